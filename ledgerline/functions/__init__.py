"""Pure Column builders shared by every report (no UDFs)."""
