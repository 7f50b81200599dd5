"""Business plans: star schema, refreshable aggregates, RFM, LTV, recommendations."""
