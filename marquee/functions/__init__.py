"""Part of the marquee engine."""
