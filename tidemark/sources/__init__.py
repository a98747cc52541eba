"""Reading and writing: discovery, typed CSV, keyed sinks, history store, periods."""
