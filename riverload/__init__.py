"""Water-discharge network and pollutant-load analytics on Spark DataFrames."""
