"""Set-at-a-time processing of web-crawl data with Spark DataFrames."""
