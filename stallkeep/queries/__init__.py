"""Registered queries: each runs an operator over whole tables and has an SQL counterpart where SQL can say it."""
