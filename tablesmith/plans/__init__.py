"""End-to-end plans: the table sync and the job registry loop."""
