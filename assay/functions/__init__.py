"""Column functions: parsing, standardising, banding, money and features."""
