"""DataFrame -> DataFrame building blocks of the plans."""
