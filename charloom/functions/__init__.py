"""Column expressions, their SQL spellings for the oracles, and the NumPy kernels
that run inside Arrow-batched tasks."""
