"""Jobs that compose sources and operators."""
