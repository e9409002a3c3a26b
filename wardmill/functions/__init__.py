"""Pure Column -> Column helpers; everything stays inside whole-stage codegen."""
