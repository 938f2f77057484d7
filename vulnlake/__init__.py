"""vulnlake: vulnerability-risk analytics as plain Spark DataFrame functions."""
