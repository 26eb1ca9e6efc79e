"""Reading: message envelopes, payload schemas, tables."""
