"""The driver's tables in banking roles, the registered queries, and their independent SQL."""
