"""Compositions: cleaning, star schema, user activity, marts, batch jobs."""
