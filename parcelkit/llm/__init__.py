"""Training-data pipeline operators on Spark (see README, section "llm")."""
