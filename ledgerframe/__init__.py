"""ledgerframe: ledger ingestion and analytics as Spark DataFrame jobs."""
