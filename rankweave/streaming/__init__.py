"""Empty on purpose: the ranking flows are batch, refreshed partition by partition (see plans.partitions)."""
