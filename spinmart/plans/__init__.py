"""The composite jobs: marts, report, crawl reshape, message tables, incremental load."""
