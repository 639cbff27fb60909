"""Public-procurement analytics as Spark DataFrame jobs: staging history, dimensions, facts, reports."""
