"""Daily market-intelligence tables as Spark jobs: raw feed, typed rows, product history, facts, marts."""
