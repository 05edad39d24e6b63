"""Analytics built from the operators: KPI reports, marts, star schema, documents."""
