"""cuota: market-share analytics over monthly financial bulletins, written as Spark DataFrame jobs."""
