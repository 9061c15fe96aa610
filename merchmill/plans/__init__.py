"""The shop's queries and jobs."""
