"""Whole queries over the tables, with equivalent SQL for checking."""
