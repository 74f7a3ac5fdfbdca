"""bankmart: audit, clean, model and measure banking tables with Spark DataFrames."""
