"""Reading ticks and bars, writing tables, staging intermediate results."""
