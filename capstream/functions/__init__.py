"""Part of capstream."""
