"""The supplied test tables as catalogue tables, the registered queries and their oracles."""
