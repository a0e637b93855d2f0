"""Named queries: KPI tables, hypotheses, measures and report datasets."""
