"""State that is kept between daily runs: first days, activity bitmaps, user sketches, partial slices."""
