"""Export queries, jobs and the registered workload."""
