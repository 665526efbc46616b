"""Column expressions (built-in functions only, codegen friendly).

dates     floor-day arithmetic, typed literals, time-zone-free text parsing
cleaning  currency, quantity, percentage, spreadsheet text, booleans
rules     stale / bad-metadata / flag / notes / score rules (null-safe)
"""
