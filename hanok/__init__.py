"""hanok: housing-trade analytics written as Spark DataFrame programs."""
