"""Daily jobs: operators put together, with their outputs written as partitioned tables."""
