"""DataFrame operators: SCD, facts, metadata, enrichment, rules, quality."""
