"""Independent SQL answers for the registered queries."""
