"""Query plans: facts, marts, reports and the end-to-end pipeline."""
