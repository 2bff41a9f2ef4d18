"""Column builders: grid indices, geohash keys, text guards, palettes."""
