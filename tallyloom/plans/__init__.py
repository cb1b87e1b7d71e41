"""The derived star and the registered queries."""
