"""Column expressions shared by the operators (splits, whole-second epochs, time buckets, device class)."""
