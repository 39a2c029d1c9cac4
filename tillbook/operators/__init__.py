"""Table operators, gold summaries and report queries."""
