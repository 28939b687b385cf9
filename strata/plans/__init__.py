"""Silver entities, gold tables, and the loads that run them."""
