"""tidewright: lakehouse ETL jobs and a trading-query workload as Spark DataFrame operators."""
