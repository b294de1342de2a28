"""Column functions: rounding, clock, mileage bands, calibration formulas."""
