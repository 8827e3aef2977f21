"""Tables, measures and reports built from operators."""
