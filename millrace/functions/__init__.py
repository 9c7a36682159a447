"""Column selection and scalar column expressions."""
