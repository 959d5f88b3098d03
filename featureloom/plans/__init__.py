"""Plans: the credit feature blocks and the driver-table query catalogue."""
