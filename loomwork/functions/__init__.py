"""Column expressions: text, chat, arrays, images, hashing."""
