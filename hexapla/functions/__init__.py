"""Part of hexapla; see README.md."""
