"""Column functions. Everything is a built-in expression except entity decoding and IPv6 text form."""
