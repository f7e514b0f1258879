"""The analysis itself: extraction, results, map colouring."""
