"""What the furniture of web pages says, in the supported languages.

Digits stand as #, the site's own name as @.
"""

#: Anchor texts of menus, post tools and legal links.
ANCHORS = """
home|about|contact|archive|recipes|menu|forum|trip reports|meal plans|gear|search|log in|sign in|shop|blog|news|faq|help|login|register|subscribe
privacy|terms|cookie settings|accessibility|sitemap|privacy policy|terms of use|imprint|report this post|quote|permalink|reply|next|previous|share|tweet|pin|print|save|rate|email|facebook
accept|accept all|reject|manage choices|more options|settings|advertisement|bookmark|skip to content|back to top|jump to recipe|print recipe|rate this recipe|change language|english|deutsch|français|español|italiano
startseite|über uns|kontakt|rezepte|ausrüstung|touren|suche|anmelden|impressum|datenschutz|agb|beitrag melden|zitieren|teilen|drucken|merken|weiter|zurück|anzeige|einstellungen|nach oben|zum inhalt springen|alle akzeptieren|ablehnen
accueil|à propos|recettes|matériel|récits|recherche|connexion|boutique|mentions légales|confidentialité|signaler|citer|partager|imprimer|épingler|enregistrer|suivante|suivant|précédent|publicité|paramétrer|haut de page|aller au contenu|tout accepter|refuser
inicio|sobre mí|recetas|equipo|rutas|tienda|buscar|entrar|contacto|aviso legal|privacidad|denunciar|citar|compartir|imprimir|guardar|siguiente|anterior|publicidad|configurar|volver arriba|saltar al contenido|aceptar todo|rechazar
chi siamo|ricette|attrezzatura|itinerari|negozio|cerca|accedi|contatti|note legali|segnala|cita|condividi|stampa|salva|avanti|indietro|pubblicità|preferenze|torna su|vai al contenuto|accetta tutto|rifiuta
início|sobre|receitas|equipamento|trilhas|loja|entrar|contato|termos|privacidade|denunciar|citar|compartilhar|imprimir|salvar|próxima|publicidade|opções|voltar ao topo|pular para o conteúdo|aceitar tudo|recusar
over ons|recepten|uitrusting|routes|winkel|zoeken|inloggen|voorwaarden|melden|citeren|delen|afdrukken|bewaren|volgende|vorige|advertentie|instellingen|naar boven|ga naar de inhoud|alles accepteren|weigeren
hem|om oss|recept|utrustning|turer|butik|sök|logga in|villkor|integritet|anmäl|citera|dela|skriv ut|spara|nästa|annons|inställningar|till toppen|hoppa till innehållet|godkänn alla|neka
etusivu|tietoa|reseptit|varusteet|retket|kauppa|haku|kirjaudu|yhteys|ehdot|tietosuoja|ilmoita|lainaa|jaa|tulosta|tallenna|seuraava|mainos|asetukset|takaisin ylös|siirry sisältöön|hyväksy kaikki|hylkää
strona główna|o nas|przepisy|sprzęt|wycieczki|sklep|szukaj|zaloguj|regulamin|prywatność|zgłoś|cytuj|udostępnij|drukuj|zapisz|dalej|reklama|ustawienia|do góry|przejdź do treści|akceptuj wszystko|odrzuć
главная|о нас|рецепты|снаряжение|походы|магазин|поиск|войти|контакты|условия|конфиденциальность|пожаловаться|цитировать|поделиться|печать|сохранить|далее|реклама|настройки|наверх|перейти к содержанию|принять все|отклонить
ホーム|このサイトについて|レシピ|道具|山行記録|検索|ログイン|お問い合わせ|ショップ|利用規約|プライバシー|報告|引用|共有|印刷|保存|次へ|前へ|広告|設定|ページの先頭へ|本文へ移動|すべて許可|拒否|通報
page #|pagina #|página #|seite #|sida #|sivu #|strona #|страница #|n° #|no #|№ #|##|permalink ##|link ##|#|courriel|correo|e-mail|e-post|sähköposti|почта|ссылка|シェアする|メール|page|pagina|página|seite|sida|sivu|strona|страница
""".strip()

#: Lines that begin so, before a colon, hold links only.
LABELS = """
related posts|popular this week|you may also like|previous|next|filed under|tags|share this|sponsored|members online|change language|rate this recipe|categories|read more|see also|more recipes
ähnliche beiträge|das könnte dir auch schmecken|schlagwörter|diesen beitrag teilen|kategorie|kategorien|weiterlesen
articles similaires|à lire aussi|étiquettes|partager sur|catégorie|catégories|vous aimerez aussi
entradas relacionadas|también te puede gustar|etiquetas|comparte|categoría|categorías|leer más
articoli correlati|potrebbe piacerti anche|tag|etichette|condividi su|categoria|categorie|leggi anche
veja também|você também pode gostar|etiquetas|marcadores|compartilhe|categorias|leia também
lees ook|misschien ook lekker|labels|trefwoorden|deel dit|categorie|categorieën|gerelateerde berichten
läs även|du kanske också gillar|etiketter|taggar|dela på|kategorier|relaterade inlägg
lue myös|saatat pitää myös|avainsanat|tunnisteet|jaa|kategoriat|tilaa uutiskirje
zobacz też|podobne wpisy|tagi|udostępnij|kategoria|może ci się spodobać
вам может понравиться|похожие записи|метки|теги|поделиться|рубрика|рубрики|читайте также
関連記事|こちらもおすすめ|タグ|共有|カテゴリー|カテゴリ|あわせて読みたい
""".strip()

#: Whole lines: notices, sign-ups, adverts, comment tools, footers.
NOTICES = """
this site sets cookies. read the privacy policy
we use cookies to improve your visit. accept all
by browsing @ you agree to our use of cookies and similar tools.
@ and # partners store data on your device. accept
@ is a reader-supported site. powered by tea. #
as an affiliate we may earn from links on @
subscribe to the @ newsletter and never miss a meal
join # readers: enter your address below
get # free trail menus in your inbox
follow us on the feed, the tube and the gram
please enable javascript to view the comments
# comments. log in to reply
leave a comment. your address will not be shown
reading time # min · bookmark
sponsored: folding spoons, # left in stock
members online: #. newest member joined today
filed under: trail food, # entries
© # @. all rights reserved.
copyright # @ · privacy · terms
page # # # … next
wir verwenden cookies, um @ zu verbessern. alle akzeptieren
mit der nutzung von @ stimmen sie der speicherung zu. mehr erfahren
diese website nutzt cookies von # partnern. ablehnen
jetzt den newsletter von @ abonnieren
# tourenrezepte gratis per post sichern
# kommentare. zum antworten bitte anmelden
schreibe einen kommentar
© # @. alle rechte vorbehalten.
nous utilisons des cookies pour améliorer @. tout accepter
en poursuivant sur @, vous acceptez nos cookies
ce site et # partenaires déposent des traceurs. refuser
abonnez-vous à la lettre de @
recevez # menus de randonnée par courriel
# commentaires. connectez-vous pour répondre
laisser un commentaire
© # @. tous droits réservés.
usamos cookies para mejorar @. aceptar todo
al seguir en @ aceptas las cookies
este sitio y sus # socios guardan datos. rechazar
suscríbete al boletín de @
recibe # menús de ruta en tu correo
# comentarios. inicia sesión para responder
deja un comentario
© # @. todos los derechos reservados.
usiamo i cookie per migliorare @. accetta tutto
continuando su @ accetti i cookie
@ e # partner salvano dati sul dispositivo. rifiuta
iscriviti alla newsletter di @
ricevi # menù da sentiero
# commenti. accedi per rispondere
lascia un commento
© # @. tutti i diritti riservati.
usamos cookies para melhorar o @. aceitar tudo
ao continuar no @ você aceita os cookies
o @ e # parceiros guardam dados. recusar
assine o boletim do @
receba # cardápios de trilha
# comentários. entre para responder
deixe um comentário
© # @. todos os direitos reservados.
wij gebruiken cookies om @ te verbeteren. alles accepteren
door verder te gaan op @ accepteer je cookies
@ en # partners slaan gegevens op. weigeren
schrijf je in voor de nieuwsbrief van @
ontvang # wandelmenu's gratis
# reacties. log in om te reageren
laat een reactie achter
© # @. alle rechten voorbehouden.
vi använder kakor för att förbättra @. godkänn alla
genom att fortsätta på @ godkänner du kakor
@ och # partner sparar data. neka
prenumerera på nyhetsbrevet från @
få # turmenyer gratis
# kommentarer. logga in för att svara
lämna en kommentar
© # @. alla rättigheter förbehållna.
käytämme evästeitä sivuston @ parantamiseen. hyväksy kaikki
jatkamalla sivustolla @ hyväksyt evästeet
@ ja # kumppania tallentavat tietoja. hylkää
tilaa uutiskirje: @
saat # retkiruokalistaa ilmaiseksi
# kommenttia. kirjaudu vastataksesi
jätä kommentti
© # @. kaikki oikeudet pidätetään.
używamy plików cookie, aby ulepszać @. akceptuj wszystko
korzystając z @ akceptujesz pliki cookie
@ i # partnerów zapisuje dane. odrzuć
zapisz się na newsletter @
odbierz # jadłospisów na szlak
# komentarzy. zaloguj się, aby odpowiedzieć
dodaj komentarz
© # @. wszelkie prawa zastrzeżone.
мы используем файлы cookie, чтобы улучшить @. принять все
оставаясь на @, вы принимаете файлы cookie
@ и # партнёров хранят данные. отклонить
подпишитесь на рассылку @
получите # походных меню
# комментариев. войдите, чтобы ответить
оставить комментарий
© # @. все права защищены.
@ではクッキーを使用しています。すべて許可
@の利用を続けるとクッキーに同意したことになります
@と#社の提携先がデータを保存します。拒否
@のメールマガジンに登録
山ごはん#品を無料で受け取る
コメント#件 返信するにはログイン
コメントを残す
© # @ 無断転載を禁じます。
""".strip()

#: Lines that are body although they hold many separators: the ingredient list.
LISTS = """
ingredients|you need|what goes in the bag|for the bag|zutaten|das kommt in den beutel|ingrédients|dans le sachet|ingredientes|para la bolsa|ingredienti|nel sacchetto|no saquinho|ingrediënten|in het zakje|ingredienser|i påsen|ainekset|pussiin|składniki|do woreczka|состав|в пакет|材料|袋に入れるもの
""".strip()

#: First links of breadcrumbs.
ROOTS = "home|startseite|start|accueil|inicio|início|hem|etusivu|strona główna|главная|ホーム"
