"""Tag definitions and the plans that compute, assemble and store them."""
