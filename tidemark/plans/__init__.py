"""SCD2 deltas and the specs of the warehouse tables."""
