"""Default rule tables. All values here are fixed: they decide which label a text gets."""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    source: str
    pattern: str
    priority: int = 99


class Brand(NamedTuple):
    key: str
    display: str
    pattern: str


# Creator type; the smallest priority wins.
CREATOR_TYPES = [
    Rule("Doctor", "profile", r"bác sĩ|bac si|bacsi|bs da lieu|bsdl|chuyen khoa da lieu|da lieu|dược sĩ|duoc si|duocsi|\bds\b|si da|ngành y|nganh y|ngành dược|nganh duoc|y khoa|y dược|y duoc|med student|medical student|clinic|medical|doctor|dr\.|\bdr\b|pharmacist|bs\.|dermatologist|derma\b|skincarebacsi|y tế|da liễu", 1),
    Rule("Beauty KOC", "both", r"for work|fw:|booking|collab|brand inbox|\bkoc\b|kocvn|kocvietnam|beautykoc|tiktokkoc|kocbeauty|reviewkoc|kocskincare|\bkol\b|\bkols\b|affiliate|pr:|hợp tác|hop tac|tài trợ|tai tro|narocnik|partner", 2),
    Rule("Mom & Baby", "both", r"mẹ bỉm|me bim|bỉm sữa|bim sua|làm mẹ|lam me|mẹ và bé|me va be|nuôi con|nuoi con|motherhood|mebimsa|bebim|mevabe", 3),
    Rule("Gym", "both", r"\bgym\b|fitness|workout|thể dục|the duc|personal trainer|yoga\b|pilates|tập luyện|tap luyen", 4),
    Rule("Skincare/Beauty", "both", r"skincare|beauty|làm đẹp|lam dep|mỹ phẩm|my pham|dưỡng da|duong da|makeup|make up|chamsocda|lamdep|goclamdep|reviewlamdep", 5),
    Rule("Lifestyle", "both", r"lifestyle|vlog\b|daily\b|cuộc sống|cuoc song|chia sẻ cuộc|chia se cuoc|xuhuong\b|fyp\b", 6),
]
# Follower bands (label, lowest, highest).
FOLLOWER_BANDS = [
    ("Nano", 0, 999),
    ("Micro", 1000, 9999),
    ("Rising", 10000, 99999),
    ("Macro", 100000, 999999),
    ("Mega", 1000000, None),
]
# Brands that count for a creator's loyalty.
CREATOR_BRANDS = [
    Brand("obagi", "Obagi", r"obagi"),
    Brand("la_roche_posay", "La Roche-Posay", r"larocheposay|larocheposayvn|lrpvn|\blrp\b|anthelios|cicaplast|effaclar|uvair|toleriane|uvmune|hyalu"),
    Brand("cerave", "CeraVe", r"cerave|ceravepartner|ceravevietnam|hợptáccùngcerave|hop_tac_cung_cerave"),
    Brand("bioderma", "Bioderma", r"bioderma|sensibio|sebium"),
    Brand("cocoon", "Cocoon", r"cocoon|cocoonvietnam|myphamthuanchay"),
]
# Other platforms named in a profile.
PLATFORM_RULES = [
    Rule("multi-platform", "description", r"\big\b|instagram|youtube|\byt\b|facebook|\bfb\b|pinterest|threads|spotify"),
]
PLATFORM_DEFAULT = "only Tiktok"
# Skin concerns of a video, several may hold.
SKIN_CONCERNS = [
    Rule("Sun Protection", "both", r"anthelios|kemchongnang|kem chong nang|uvair|uvmune|sunscreen|chongnang|\bspf\b|everydaysunscreen|suncare"),
    Rule("Acne", "both", r"effaclar|acne|mun\b|muncam|munviem|sebium|dadaumun|trimun"),
    Rule("Moisturizing", "both", r"cicaplast|duongam|duong am|moisturiz|phuchoida|barrier|baume|kemduong|kem duong"),
    Rule("Cleansing", "both", r"suaruamat|sua rua mat|gelruamat|cleanser|ruamat|nuoctaytrang|nuoc tay trang|trangdiem|trang diem|taytrang"),
    Rule("Exfoliating", "both", r"taytebaochet|tay te bao chet|bhatoner|bha\b|exfoliat|aha\b|peel\b"),
    Rule("Brightening", "both", r"lamsang|lam sang|brighten|vitaminc|vitamin c|trangda|melab3|melab"),
    Rule("Anti-aging", "both", r"retinol|chong lao hoa|chonglaohoa|antiaging|anti aging|collagen|elastiderm|wrinkle"),
]
# Label of a video that only shows general skincare words.
SKINCARE_FALLBACK = Rule("Skincare", "both", r"\bskincare\b|skincaretips|skincareroutine|skincareproducts|skincareviral|skincare101|chamsocda|cham soc da|goclamdep|lamdep|mypham")
# Product types of a video, several may hold.
PRODUCT_TYPES = [
    Rule("Sunscreen", "both", r"kemchongnang|kem chong nang|sunscreen|\bspf\b|anthelios|uvmune|uvair"),
    Rule("Cleanser", "both", r"suaruamat|sua rua mat|gelruamat|gel rua mat|cleanser|rua mat|suaruamatcerave"),
    Rule("Serum", "both", r"\bserum\b|tinhchat|tinh chat|serumobagi|sebiumserum"),
    Rule("Moisturizer", "both", r"kemduong|kem duong|moisturiz|cicaplast|duongam|baume"),
    Rule("Toner", "both", r"\btoner\b|nuochoahong|nuoc hoa hong|essence|bhatoner"),
    Rule("Eye Cream", "both", r"kemmat|kem mat|eye cream|eyecream"),
    Rule("Micellar", "both", r"micellar|micelar|nuoctaytrang|nuoc tay trang|taytrang"),
]
# Paid partnership.
PARTNERSHIP = [
    Rule("True", "both", r"#ad\b|\bad\b|hợptáccùng|hop_tac_cung|hoptaccung|partner|collab|narocnik|tài trợ|tai tro|sponsored|taitro"),
]
# Content type; the earliest keyword wins, priority breaks ties.
CONTENT_TYPES = [
    Rule("Sponsored/Partnership", "both", r"#ad\b|\bad\b|hợptáccùng|hop_tac_cung|hoptaccung|partner|collab|narocnik|tài trợ|tai tro|sponsored|taitro|hợp tác|hop tac", 1),
    Rule("Review", "both", r"\breview\b|riview|đánh giá|danh gia|reviewlamdep|reviewskincare|honestreview|thật tình|that tinh|có nên mua|co nen mua", 2),
    Rule("Tutorial", "both", r"tutorial|howto|how to|cách dùng|cach dung|hướng dẫn|huong dan|skincareroutine|routine\b|skincaretips|tip skincare|step\b", 3),
    Rule("Unboxing", "both", r"unbox|unboxing|mở hộp|mo hop|nhận được|nhan duoc|haul\b|opening\b", 4),
]
# Brands tagged on videos (key, display).
VIDEO_BRANDS = [
    ("obagi", "Obagi"),
    ("la_roche_posay", "La Roche-Posay"),
    ("cerave", "CeraVe"),
    ("bioderma", "Bioderma"),
    ("cocoon", "Cocoon"),
    ("vichy", "Vichy"),
    ("eucerin", "Eucerin"),
    ("cetaphil", "Cetaphil"),
    ("svr", "SVR"),
    ("torriden", "Torriden"),
]
# Hashtags of the brands that have defaults.
BRAND_HASHTAGS = {
    "vichy": ["vichy", "vichyvietnam", "vichyvn", "vichypartner"],
    "eucerin": ["eucerin", "eucerinvietnam", "eucerinvn"],
    "cetaphil": ["cetaphil", "cetaphilvietnam", "cetaphilvn"],
    "svr": ["svr", "svrvietnam", "svrparis", "svr_sebiaclear", "sebiaclear"],
    "torriden": ["torriden", "torridenvn", "torridenvietnam"],
}
# Patterns beside the brand hashtags.
BRAND_EXTRA = {
    "la_roche_posay": r"lrpvn|\blrp\b|uvair|toleriane|uvmune|hyalu|melab3|melab",
    "cerave": r"ceraveskincare",
    "obagi": r"nugen|khoahocobagi",
    "bioderma": r"sensibio|sebium",
    "cocoon": r"nuoctaytrangbidao|taytebaochet",
    "vichy": r"vichyvn|vichypartner|meandmycollagen",
    "eucerin": r"eucerinvn|eucerinvietnam",
    "cetaphil": r"cetaphilvn|cetaphilvietnam",
    "svr": r"svrparis|svrvietnam|sebiaclear",
    "torriden": r"torridenvn|torridenvietnam",
}
# Words of gift listings, checked before any category.
GIFT_WORDS = ["tang kem", "qua tang", "freegift", "free gift"]
# Product categories, first match wins.
PRODUCT_CATEGORIES = [
    ("Combo (Shampoo and hair conditioner)", ["dau goi va dau xa", "combo dau goi"]),
    ("Shampoo", ["dau goi"]),
    ("Hair conditioner", ["dau xa"]),
    ("Hair styling for men", ["sap vuot toc", "tao kieu"]),
    ("Facewash", ["rua mat"]),
    ("Deodorant", ["khu mui", "lan khu mui"]),
    ("Bodymist", ["body mist"]),
    ("Perfume", ["nuoc hoa"]),
    ("Shower gel", ["sua tam"]),
]
# Target audience, first match wins, Unisex without a match.
AUDIENCES = [
    ("Unisex", ["unisex", "ca gia dinh"]),
    ("Male", ["nam"]),
    ("Female", ["nu"]),
]
# Hashtags that say nothing about a category.
STOP_TAGS = ["xuhuong", "fyp", "foryou", "viral", "trending", "capcut", "xh", "xhtiktok", "reviewdung"]
