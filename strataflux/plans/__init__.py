"""Jobs: operators wired to tables, with what makes a run safe to repeat."""
