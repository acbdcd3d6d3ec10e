"""Star build, analytic queries, views and the benchmark star."""
