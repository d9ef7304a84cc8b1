"""skyledger: station-day quality, change and completeness analytics as Spark DataFrame operators."""
