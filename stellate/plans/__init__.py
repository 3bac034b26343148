"""Multi-step plans: conform steps of the star schema and the warehouse load."""
