"""Column helpers shared by the operators; every helper takes and returns ``Column``."""
