"""The README's Python example runs as written (paths redirected to micro files)."""

from pathlib import Path

README = Path(__file__).resolve().parents[1] / "README.md"
FILES = {
    "postcode_ranges.csv": "locality,postcode_range\nAlpha,01000-000 a 01003-999\n",
    "customers.csv": "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
                     "c1,u1,01002,x,SP\nc2,u2,99999,y,BA\n",
    "order_payments.csv": "order_id,payment_installments\no1,2.0\no2,abc\n",
    "order_reviews.csv": 'review_id,msg\nr1,"a, ""b""\nc"\n',
}


def test_readme_python_example(spark, tmp_path):
    text = README.read_text(encoding="utf-8")
    code = text.split("## Using the library from Python")[1].split("```python")[1].split("```")[0]
    for name, content in FILES.items():
        (tmp_path / name).write_text(content, encoding="utf-8")
        code = code.replace(f'"{name}"', f'"{tmp_path / name}"')
    ns: dict = {}
    exec(compile(code, "README.md", "exec"), ns)  # noqa: S102 - documentation example
    customers = {r.customer_id: (r.customer_city, r.customer_region) for r in ns["customers"].collect()}
    assert customers == {"c1": ("alpha", "sudeste"), "c2": (None, "nordeste")}
    assert sorted((r.order_id, r.payment_installments) for r in ns["payments"].collect()) == [
        ("o1", 2), ("o2", None)]
    assert ns["reviews"].first().msg == 'a, "b"\nc'
