"""Column expressions: text, numbers, dates. All built-in, no UDFs."""
