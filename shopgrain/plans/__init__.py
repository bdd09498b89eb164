"""The jobs: questions, star loads, paired queries, layouts, trips, audits and profiles."""
