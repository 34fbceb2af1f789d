"""tickloom: market-microstructure analytics on trade ticks, as Spark DataFrame operators."""
