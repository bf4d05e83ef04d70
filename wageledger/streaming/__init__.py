"""Loading the landing folder as a stream."""
