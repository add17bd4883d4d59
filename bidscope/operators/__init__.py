"""DataFrame operators: facts, metrics, daily KPIs, checks."""
