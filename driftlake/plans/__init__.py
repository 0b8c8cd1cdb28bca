"""Dashboard queries: marts over the lake tables and panels over the marts."""
