"""The warehouse itself: conformance, dimensions, facts, validation, measures."""
