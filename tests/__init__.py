"""A package, so that test_queries.py here and the one in llm are modules of different names."""
