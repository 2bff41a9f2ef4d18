"""DataFrame operators: pixels, pyramids, tiles, GPS, places, statistics, serving."""
