"""Command-line jobs (``spark-submit -m`` style entry points) over the operators."""
