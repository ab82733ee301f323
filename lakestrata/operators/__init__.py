"""Data operators: silver typing, FK checks, gold entities, reports, assertions."""
