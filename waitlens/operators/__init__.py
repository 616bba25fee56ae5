"""Generic DataFrame operators used by the domain pipelines."""
