"""Web-traffic analytics as Spark jobs: clean beacon logs, then report any metric at any grain."""
