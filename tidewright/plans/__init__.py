"""Table jobs and the named query workload."""
