"""Named query registry, its oracle SQL and one module per workload."""
