"""Ready plans: the operators put together for each workload."""
