"""The operators on the shared test tables, each with the same question in plain SQL."""
