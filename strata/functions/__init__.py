"""Column functions: masks, access checks, audit and type helpers."""
