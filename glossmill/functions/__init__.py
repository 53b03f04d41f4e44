"""Part of glossmill."""
