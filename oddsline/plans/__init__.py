"""Stage drivers: chain operators and write their outputs."""
