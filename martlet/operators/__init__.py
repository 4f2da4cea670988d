"""DataFrame operators: staging, intermediate models, marts, panels, insights, scoring, checks."""
