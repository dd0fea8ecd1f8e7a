"""The operators on the given test tables, each with its SQL twin where SQL can express it."""
