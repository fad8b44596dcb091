"""The batch jobs, each a composition of operators."""
