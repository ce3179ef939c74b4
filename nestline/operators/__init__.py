"""DataFrame -> DataFrame operators: no paths, no actions, no Python UDFs."""
