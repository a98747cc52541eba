"""SCD2 on micro-batches."""
