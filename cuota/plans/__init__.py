"""End-to-end jobs built from the operators, and their bindings to the check tables."""
