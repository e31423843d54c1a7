"""DataFrame to DataFrame operators. None of them reads a path; only model fits and slicing run jobs."""
