"""Part of skyledger."""
