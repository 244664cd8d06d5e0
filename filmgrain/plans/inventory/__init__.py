"""The operator inventory, run over the catalogue views."""
