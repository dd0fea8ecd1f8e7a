"""The three weekly jobs (catalog, readings cache, report) put together from the operators."""
