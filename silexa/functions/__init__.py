"""Column functions and small Python kernels that several operators share."""
