"""Web-archiving jobs on Spark: find the URLs of many sites, submit them, keep one result row each."""
