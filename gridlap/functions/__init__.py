"""Part of gridlap."""
