"""The two reports, their SQL-report variants and the jobs that write them."""
