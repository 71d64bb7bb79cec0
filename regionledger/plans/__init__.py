"""Multi-step jobs: source clean-up, benchmark fact, totals, reconciliation."""
