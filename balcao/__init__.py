"""Sales targets, commissions and branch scorecards for a retail chain, as Spark jobs."""
