"""Multi-step plans: cleaning, the star schema and the written warehouse."""
