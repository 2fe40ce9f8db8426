"""Functions from DataFrame to DataFrame; table, key and measure columns are arguments."""
