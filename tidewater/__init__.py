"""tidewater: supply-chain analytics as Spark DataFrame jobs."""
