"""Reading partitioned inputs and writing re-runnable outputs."""
