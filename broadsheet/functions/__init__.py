"""Column functions: text, language, classification, places, geometry, keys and formats."""
