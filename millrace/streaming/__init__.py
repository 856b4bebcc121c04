"""Event handling: the same functions serve a batch frame and a stream."""
