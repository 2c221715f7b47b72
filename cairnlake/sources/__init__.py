"""Feed declarations and the landing-to-bronze readers and writers."""
