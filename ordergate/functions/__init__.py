"""Column-level building blocks: coercion, row rules, masking, rounding, SLA flags."""
